import re
from collections import defaultdict

import pytest

from tidemark.llm import decontaminate as op
from tidemark.llm.common import read

ITEM = ("On market day the farmer sold 12 apples to Maria for 3 dollars and then Maria gave 12 apples "
        "back to old Peter who thanked Maria twice before walking home")
PAD = "some words that have nothing to do with any question at all stand around here and there "


@pytest.fixture()
def bench(spark):
    return spark.createDataFrame([(0, ITEM, "x"), (1, "too short an item", "x"), (2, None, "x"), (3, "", "x")], "item_id long, text string, hash string")


CASES = {
    1: ITEM, 2: PAD + ITEM + ". " + PAD, 3: PAD + ITEM.lower() + " " + PAD, 4: PAD + ITEM.upper() + "\n" + PAD,
    5: PAD + ITEM.replace("12", "57").replace("Maria", "Anna").replace("Peter", "Olaf").replace("3", "8") + " " + PAD,  # other values, used alike
    6: PAD + ITEM.replace("dollars", "euros").replace("3", "9.50") + " " + PAD,
    7: PAD + ITEM.replace(" ", " , ") + PAD,
    8: PAD + ITEM.replace("then Maria gave", "then quickly Maria gave") + " " + PAD,  # a word more
}
CLEAN = {
    21: PAD, 22: PAD + ITEM[:70] + PAD, 23: None, 24: "", 25: "12 12 12 12 12 12 12",
    # the same template with names that do not map one to one
    26: PAD + ITEM.replace("Maria", "Anna", 1).replace("Maria", "Berta", 1).replace("Maria", "Clara") + " " + PAD,
    27: PAD + ITEM.replace("12", "57", 1).replace("Maria", "Anna") + " " + PAD,
    28: " ".join(sorted(ITEM.split())),
}


def test_cases(docs_of, bench):
    got = {r["doc_id"]: r for r in op.decontaminate(docs_of([*CASES.items(), *CLEAN.items()]), bench).collect()}
    assert {i for i in got if got[i]["contaminated"]} == set(CASES)
    assert got[1]["item_ids"] == [0] and got[1]["share"] == 1.0 and got[21]["n_items"] == 0


def plain_words(t):
    return [m.group(0).lower() for m in re.finditer(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+(?:[.,]\d+)*", t or "")]


def test_brute_force(spark):
    """On text without numbers and with few names, an item is found where its words are, in a row, to 0.8 at least."""
    sf = "/root/testdata/sf0.01"
    docs, items = read(spark, sf, "documents"), read(spark, sf, "benchmark")
    got = {r["doc_id"]: set(r["item_ids"]) for r in op.decontaminate(docs, items).collect() if r["contaminated"]}
    want = defaultdict(set)
    bench = [(r["item_id"], plain_words(r["text"])) for r in items.collect()]
    for d in docs.collect():
        w = plain_words(d["text"])
        at = defaultdict(list)
        for p in range(len(w) - 4):
            at[tuple(w[p : p + 5])].append(p)
        for i, b in bench:
            lines = defaultdict(set)
            for k in range(len(b) - 4):
                for p in at.get(tuple(b[k : k + 5]), ()):
                    for g in (0, 1):
                        lines[g, (p - k + g * len(b)) // (2 * len(b))] |= set(range(k, k + 5))
            if lines and max(map(len, lines.values())) >= 0.8 * len(b):
                want[d["doc_id"]].add(i)
    assert got == dict(want) and len(want) > 5


def test_no_python_in_the_plan(spark):
    plan = op.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_odd_rows(odd_docs, no_docs, bench):
    assert op.decontaminate(odd_docs, bench).filter("contaminated").count() == 0
    assert op.decontaminate(odd_docs, bench).count() == 11
    assert op.decontaminate(no_docs, bench).count() == 0
    assert op.decontaminate(odd_docs, bench.limit(0)).filter("contaminated").count() == 0


def test_stage_keeps_clean_documents(spark, docs_of, tmp_path):
    docs_of([]).sparkSession.createDataFrame([(0, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = docs_of([*CASES.items(), *CLEAN.items(), (None, PAD)])
    out = op.stage_decontaminate(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == {*CLEAN, None}


OPENING = ["Tom has 3 apples. Tom buys 4 more apples. How many apples does Tom have?",
           "Anna walked 5 km. Anna then ran 7 km to the old mill. How far did Anna go in total?"]


def test_names_that_open_sentences(spark, docs_of):
    bench = spark.createDataFrame(list(enumerate(OPENING)), "item_id long, text string")
    tom, anna = OPENING
    docs = [(1, PAD + tom.replace("Tom", "Ben").replace("3", "5").replace("4", "9")), (2, PAD + anna.replace("Anna", "Zoe").replace("5", "6").replace("7", "11")),
            (3, tom.lower()), (4, PAD + ". " + anna + " " + PAD), (5, PAD + tom.replace("Tom buys", "Ben buys")), (6, PAD + anna.replace("Anna then", "Zoe then"))]
    got = {r["doc_id"]: r["item_ids"] for r in op.decontaminate(docs_of(docs), bench).collect()}
    assert {i: x for i, x in got.items() if x} == {1: [0], 2: [1], 3: [0], 4: [1]}


def test_words_put_into_an_item(spark, docs_of, bench):
    """As many words as the item has may stand between its halves; an item whose halves are further apart is not found."""
    w = ITEM.split()
    split = lambda n: PAD + " ".join(w[:14] + [f"extra{'abcdefgh'[i % 8]}" for i in range(n)] + w[14:]) + " " + PAD
    docs = [(n, split(n)) for n in (0, 1, 7, 8, 9, 12, 20, len(w))] + [(500, split(4 * len(w)))]
    got = {r["doc_id"]: r["contaminated"] for r in op.decontaminate(docs_of(docs), bench).collect()}
    assert not got.pop(500) and all(got.values())


def test_null_and_shared_ids(docs_of, bench):
    got = op.decontaminate(docs_of([(None, ITEM), (None, PAD), (None, None), (7, ITEM), (7, PAD), (8, ITEM), (8, ITEM)]), bench).collect()
    flags = sorted((r["doc_id"] or 0, r["contaminated"]) for r in got)
    assert flags == [(0, False), (0, False), (0, True), (7, False), (7, True), (8, True), (8, True)]


REPEATS = [
    "The farmer paid 3 dollars for hay, 4 dollars for hay, 6 dollars for hay. How much did the farmer pay for all of the hay",
    "Each child has 3 apples and 4 apples and 5 apples in the basket and 4 apples and 3 apples on the table",
]


def test_repeated_phrases_and_coinciding_values(spark, docs_of):
    """An item that repeats a phrase meets itself at other shifts too; different values may become equal ones."""
    bench = spark.createDataFrame(list(enumerate(REPEATS)), "item_id long, text string")
    docs = [(10 * k + i, "pad " * k + t + " " + PAD) for i, t in enumerate(REPEATS) for k in range(8)]
    docs += [(200, PAD + REPEATS[0].replace("4", "3").replace("6", "3")), (201, PAD + REPEATS[1].replace("3", "8").replace("4", "9").replace("5", "9")),
             (202, PAD + REPEATS[0].replace(". How", ". So how"))]
    got = {r["doc_id"]: r["item_ids"] for r in op.decontaminate(docs_of(docs), bench).collect()}
    assert all(got[10 * k + i] == [i] for i in (0, 1) for k in range(8))
    assert got[200] == [0] and got[201] == [1] and got[202] == [0]


NUMBERS = ["What comes next in this row: 1 2 3 5 8 13 21 34 55 89 144", "Add 12 + 15 + 18 + 21 + 24 + 27 + 30", "7 * 8 = ?", "yes", "2 4 6 8 10"]


def test_items_of_numbers_and_short_items(spark, docs_of):
    bench = spark.createDataFrame(list(enumerate(NUMBERS)), "item_id long, text string")
    docs = [(k, f"{PAD}\n{t}\n{PAD}") for k, t in enumerate(NUMBERS)] + [(10, "YES "), (11, "7  *  8=?"), (12, PAD + "7 8 and 7 * 8 = 56"),
            (13, PAD + "1 2 3 5 8 14 22 and 11 22 33 44 55"), (14, None), (15, ""), (16, "2 4 6 8 10"), (17, PAD + "yes")]
    got = {r["doc_id"]: r["item_ids"] for r in op.decontaminate(docs_of(docs), bench).collect()}
    assert {i: x for i, x in got.items() if x} == {0: [0], 1: [1], 2: [2], 4: [4], 10: [3], 11: [2], 16: [4]}


def test_texts_are_taken_apart_once_and_after_the_joins(docs_of, bench, monkeypatch):
    """No filter on a text's words: it would be put before the joins that leave few texts, and take all texts apart again."""
    plans, stage = {}, op.stage

    def seen(df, tag):
        plans[tag] = df._jdf.queryExecution().optimizedPlan().toString()
        return stage(df, tag)

    monkeypatch.setattr(op, "stage", seen)
    found = op.findings(docs_of([*CASES.items(), *CLEAN.items()]), bench)
    assert {r["doc_id"] for r in found.collect()} == set(CASES)
    plans["found"] = found._jdf.queryExecution().optimizedPlan().toString()
    assert {"near", "met"} <= set(plans)
    for tag in ("near", "met", "found"):
        assert not [x for x in plans[tag].splitlines() if "Filter" in x and "regexp_extract_all" in x], tag
    assert plans["near"].count("regexp_extract_all") == 1


def test_anchor_hashes_meet_at_every_length(spark):
    """The hash of an anchor is that of its words at their place in a text."""
    r = spark.sql("SELECT array('a', 'b', 'c', 'd') AS w, array('b', 'c', 'd') AS a, 1 AS at")
    for n in (1, 2, 3):
        assert r.select((op.gram(op.F.col("w"), n, op.F.col("at")) == op.gram(op.F.col("a"), n)).alias("same")).first()["same"]
