from chronokey.llm import toxicity as X
from chronokey.llm.common import documents

from .cases import edge_documents, empty_documents

LEXICON = X.Lexicon(["moron", "lowei*"])


def found(text):
    return {k: n for k, n in LEXICON.matches(text)[0].items() if n}


def test_clauses():
    assert found("you are a moron") == {("insult", "t"): 1}
    assert found("a moron he said. fine") == {("insult", "t"): 1}
    assert found("a moron. you") == {("insult", ""): 1}
    assert found("not a moron") == {("insult", "n"): 1}
    assert found("not one two three four moron") == {("insult", ""): 1}
    assert found("he said moron") == {("insult", "rt"): 1}
    assert found("they kill us; Loweischaft loweikeit!") == {("threat", "t"): 1, ("insult", ""): 2}
    assert found("nothing here. at all") == {}
    assert LEXICON.matches("moron moron. moron x lowein") == ({("insult", ""): 4}, 2, 2)


def test_endless_clause_stays_bounded():
    assert found("moron " * 5000)[("insult", "")] == 5000


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    rows = X.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert right >= 0.97 * len(rows)
    assert sum(r["predicted"] for r in rows if r["toxic"] == 0) <= 0.01 * len(rows)
    pos, neg = ([r["score"] for r in rows if r["toxic"] == y] for y in (1, 0))
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    assert auc > 0.93


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (2, 0), (2, 0), (3, None)], "doc_id long, toxic int")
    docs = edge_documents(spark)
    rows = X.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert X.drop_toxic(docs, labels).columns == docs.columns
    assert X.toxicity(empty_documents(spark), labels).count() == 0
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r["predicted"] == 0 for r in X.toxicity(docs, nothing).collect())
    assert X.drop_toxic(docs, nothing).count() == docs.count()


def test_labels_of_held_out_rows_are_not_read(spark):
    import zlib

    sf = "/root/testdata/sf0.001"
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    turned = spark.createDataFrame([(r[0], 1 - r[1] if zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[1]) for r in labels.collect()], labels.schema)
    assert sorted(X.toxicity(docs, labels).collect()) == sorted(X.toxicity(docs, turned).collect())
