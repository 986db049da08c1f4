"""The pipeline on a small planted table, stage by stage and against brute force."""

import random

import corpus_pipeline as CP
from meterflow.llm import queries as Q

from test_operators import brute_components, prose


def test_pipeline(spark, make_docs, tmp_path):
    rnd = random.Random(10)
    base = {i: f"{prose(rnd, 80)}\n{prose(rnd, 12)}" for i in range(60)}
    item, line = prose(rnd, 30), "the same long line stands at the end of many documents"
    for i in range(0, 12):
        base[i] += f"\n{line}"
    base |= {100 + i: base[20 + i].replace("ka", "ke", 1) for i in range(5)}  # near copies
    base |= {200: f"{prose(rnd, 40)} {item} {prose(rnd, 40)}", 201: base[30], 300: "", 301: None}
    toxic = {}
    for i in range(400, 640):
        words = prose(rnd, 60).split()
        toxic[i] = int(i < 480)
        if toxic[i]:
            for _ in range(2):
                words.insert(rnd.randrange(60), rnd.choice(["dolt", "nitwit"]))
        base[i] = " ".join(words)
    sf = str(tmp_path)
    make_docs(base).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in CP.STAGES:
        docs = CP.keep(stage(spark, docs, sf), f"test-{name}")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    texts = lambda name: {r.doc_id: r.text for r in seen[name].collect()}
    assert set(base) - set(texts("toxicity")) == {i for i, t in toxic.items() if t}
    lines = texts("line_dedup")
    assert [i for i in range(12) if line in lines[i]] == [11]
    assert set(texts("jaccard_join")) == {i for i, (_, c) in brute_components(lines).items() if i == c}
    assert set(texts("jaccard_join")) - set(texts("decontamination")) == {200}
    assert {r.doc_id for r in docs.collect()} == set(texts("decontamination"))
    assert CP.run(spark, sf).count() == docs.count()


def test_pipeline_on_empty_tables(spark, make_docs, tmp_path):
    sf = str(tmp_path)
    make_docs({}).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert CP.run(spark, sf).count() == 0
    assert set(Q.ORACLE_SQL) <= set(Q.QUERIES)


def test_rows_that_share_an_id(spark, make_docs):
    """One row of each id stays, the same one however the rows are dealt."""
    rows = [(5, "one text"), (5, "another text"), (5, "one text"), (6, None), (6, None), (7, "alone"), (None, "x"), (None, "x")]
    kept = []
    for parts in (1, 5):
        docs = make_docs(rows, "n int, text_hash string").repartition(parts)
        out = CP.drop_near_duplicates(spark, docs, "")
        assert out.columns == docs.columns
        kept.append(sorted((str(r.doc_id), str(r.text)) for r in out.collect()))
    assert kept[0] == kept[1] and [i for i, _ in kept[0]] == ["5", "6", "7", "None", "None"]
