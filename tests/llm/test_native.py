from quantpanel.llm.decontamination import contaminated
from quantpanel.llm.line_dedup import remove_repeated_lines
from tests.llm.tables import awkward, documents


def test_later_windows_go_and_overlaps_merge(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb"), (4, "q\nq\nq\nq\nq"), (5, "a\nb\nc"), (6, ""), (7, None)]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in remove_repeated_lines(documents(spark, rows)).collect()}
    assert got == {
        1: (4, 0, "a\nb\nc\nd"), 2: (6, 4, "x\ny"), 3: (2, 0, "a\nb"), 4: (5, 4, "q"), 5: (3, 3, ""), 6: (1, 0, ""), 7: (0, 0, None),
    }


def test_line_dedup_awkward_rows(spark):
    assert remove_repeated_lines(awkward(spark)).count() == 13
    assert remove_repeated_lines(documents(spark, [])).count() == 0


def test_contained_items_are_found(spark):
    item = " ".join(f"w{i}" for i in range(20))
    most = " ".join(f"w{i}" for i in range(18)) + " other"  # 14 of 16 shingles
    some = " ".join(f"w{i}" for i in range(15))  # 11 of 16
    filler = " ".join(f"f{i}" for i in range(3000))
    docs = documents(spark, [(1, f"{filler} {item.upper()}\n{filler}"), (2, most), (3, some), (4, "one two"), (5, None)])
    items = spark.createDataFrame([(10, item), (11, "ONE two"), (12, ""), (13, None), (None, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_shingles) for r in contaminated(docs, items).collect()}
    assert got == {(1, 10): (16, 16), (2, 10): (14, 16), (4, 11): (1, 1)}


def test_decontamination_awkward_rows(spark):
    items = spark.createDataFrame([(1, "a"), (1, "a"), (2, "zzz")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(awkward(spark), items).collect()}
    assert got == {(3, 1), (4, 1), (5, 1)}
    assert contaminated(documents(spark, []), items).count() == 0
    assert contaminated(awkward(spark), items.where("false")).count() == 0
