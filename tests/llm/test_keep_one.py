"""Groups of the similarity join are told apart by their own label, not by their smallest id."""

from profilerank.llm import jaccard


def test_unlike_texts_with_one_id_all_stay(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(None, one), (None, two), (7, one + " end"), (5, two), (5, three), (5, three), (None, "x y z"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = sorted(((r["doc_id"], r["text"]) for r in jaccard.keep_one(docs).collect()), key=repr)
    # Null goes to an id in its group; id 5 has two unlike texts, one of them twice.
    assert found == sorted([(7, one + " end"), (5, two), (5, three), (None, "x y z"), (6, None)], key=repr)
    nulls = docs.where("doc_id is null")
    assert sorted(r["text"] for r in jaccard.keep_one(nulls).collect()) == sorted([one, two, "x y z"])
