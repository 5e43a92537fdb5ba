"""F1 of round 2: the driver gives memory back where the pipeline and its operators leave most."""

from corpusmill.llm import graph, minhash, storage, toxicity


def test_driver_and_its_jvm_give_memory_back(spark, monkeypatch):
    said = storage.give_back_driver(spark)
    version = spark._jvm.java.lang.System.getProperty("java.version")
    assert "Trim native heap" in said if [int(x) for x in version.split(".")] >= [17, 0, 9] else said is None
    seen = []
    for module in (graph, minhash, toxicity):
        monkeypatch.setattr(module, "give_back_driver", lambda _, name=module.__name__.rpartition(".")[2]: seen.append(name))
    found = graph.components(spark.createDataFrame([(3, 2), (2, 1), (7, 5)], "a long, b long"))
    assert {(r["node"], r["component"]) for r in found.collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (7, 5)}
    assert seen and set(seen) == {"graph"}
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (3, "idiot"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (3, 1)], "doc_id long, toxic int")
    assert minhash.near_duplicates(docs).where("kept").count() == 3
    assert "minhash" in seen and "toxicity" not in seen
    assert toxicity.score(docs, toxicity.fit(docs, labels)).count() == 4
    assert seen[-1] == "toxicity"
